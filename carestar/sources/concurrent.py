"""Submit independent Spark jobs together (e.g. one write per table) so the
scheduler runs their stages side by side instead of one job at a time."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

MAX_CONCURRENT_JOBS = 8

# Thread-local job properties a caller may have set (job group for
# cancellation and accounting, description, fair-scheduler pool); worker
# threads get the caller's values.
_PROPS = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel",
          "spark.scheduler.pool")


def run_concurrently(fn, items, max_workers: int = MAX_CONCURRENT_JOBS) -> dict:
    items = list(items)
    if not items:
        return {}
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    props = {k: sc.getLocalProperty(k) for k in _PROPS} if sc else {}

    def run(item):
        for k, v in props.items():
            if v is not None:
                sc.setLocalProperty(k, v)
        return fn(item)

    with ThreadPoolExecutor(max_workers=min(max_workers, len(items))) as pool:
        return dict(zip(items, pool.map(run, items)))
