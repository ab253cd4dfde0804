"""The whole claims pipeline on real CSV files, as one Spark application.

    python -m carestar.app --csv <folder of claims CSVs> --out <output folder>

1. ingest every claims CSV with explicit schemas into Parquet (L0),
2. build the star over the ingested tables (all tables written, the facts
   partitioned by year),
3. write every report as Parquet, the BI tables as Parquet and CSV (L26),
   the fact exports as gzip JSON Lines (L44-L46), the dashboard document as
   JSON (L40), the slicer and search documents as parts with a manifest
   (L41, L43).

Every step is a distributed job; independent writes are submitted together.
"""

from __future__ import annotations

import argparse
import posixpath

from pyspark.sql import SparkSession

from carestar.config import REFERENCE, Profile
from carestar.plans import bi, dashboard
from carestar.sources import ingest, sinks
from carestar.sources.concurrent import run_concurrently
from carestar.sources.tables import STAR_NAMES, Star
from carestar.sources.warehouse import write_raw, write_star


def build_from_csv(spark: SparkSession, csv_dir: str, out_dir: str,
                   profile: Profile = REFERENCE, extra: dict[str, str] | None = None) -> Star:
    """Steps 1-2: ingest and build the star; returns it."""
    from carestar.plans.star import build_star

    landing = posixpath.join(out_dir, "ingested")
    ingest.ingest_raw(spark, csv_dir, landing, extra)
    # Rows with a field that did not parse, or with too many or too few fields.
    sinks.write_parquet(ingest.rejected_counts(spark, landing),
                        posixpath.join(out_dir, "reports", "rejected_rows"))
    raw = ingest.load_raw(spark, landing, profile)
    root = posixpath.join(out_dir, "warehouse")
    return write_star(build_star(write_raw(raw, root)), root)


def write_reports(star: Star, out_dir: str) -> dict[str, str]:
    """Step 3: every registered report job as Parquet, plus the documents."""
    from carestar.registry import JOBS

    reports = posixpath.join(out_dir, "reports")
    # Not reports: the star tables (already written or views), the BI tables
    # and fact exports (written below), the documents (written below), and
    # the interactive filters, which take a user's selection.
    skip = {"dashboard_document", "slicer_domains", "search_domains", "filters_document",
            "search_document", "sliced_totals",
            "drug_search", "condition_cohort_fills", "leaderboard_sliced"}
    skip |= set(STAR_NAMES)
    names = [n for n in JOBS if n not in skip and not n.startswith(("bi_", "export_"))]

    def one(name):
        p = posixpath.join(reports, name)
        sinks.write_parquet(JOBS[name](star), p)
        return p

    paths = run_concurrently(one, names)
    docs = posixpath.join(out_dir, "documents")
    sinks.write_document(dashboard.dashboard_document(star), posixpath.join(docs, "dashboard"))
    sinks.write_parts(dashboard.filters_document(star), posixpath.join(docs, "filters"))
    sinks.write_parts(dashboard.search_document(star), posixpath.join(docs, "search"))
    paths.update(bi.export_bi(star, posixpath.join(out_dir, "exports")))
    paths.update(bi.export_facts(star, posixpath.join(out_dir, "exports")))
    return paths


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--csv", required=True, help="folder with <table>.csv files")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--cdc", help="optional extra CSV loaded and counted only")
    ap.add_argument("--shuffle-partitions", type=int, default=2000,
                    help="upper bound; AQE coalesces small shuffles")
    ap.add_argument("--as-of", default=REFERENCE.as_of.isoformat(),
                    help="date ages are computed against (YYYY-MM-DD)")
    ap.add_argument("--spine", default="2010-01-01:2030-12-31",
                    help="date dimension bounds START:END, or 'facts' for the years the facts cover")
    args = ap.parse_args(argv)
    import datetime as dt
    from carestar.session import build_session
    if args.spine == "facts":
        lo = hi = None
    else:
        lo, hi = (dt.date.fromisoformat(x) for x in args.spine.split(":"))
    profile = Profile(as_of=dt.date.fromisoformat(args.as_of), spine_start=lo, spine_end=hi)
    spark = build_session(master=None, shuffle_partitions=args.shuffle_partitions)
    star = build_from_csv(spark, args.csv, args.out, profile=profile,
                          extra={"cdc_drug_overdose": args.cdc} if args.cdc else None)
    for k, v in sorted(write_reports(star, args.out).items()):
        print(k, v)


if __name__ == "__main__":
    main()
