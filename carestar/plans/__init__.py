"""Named data jobs.  Each is ``job(star, **params) -> DataFrame``."""
