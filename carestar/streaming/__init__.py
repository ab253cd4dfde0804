"""Incremental ingest with Structured Streaming.

The reference has no stream; its only incremental step adds a table to an
existing store without rebuilding (a later CSV drop).  Here new CSV files
of a raw table are appended to its Parquet folder by a file-source stream
with ``availableNow``: each run picks up exactly the files not yet seen,
tracked in a checkpoint in the shared checkpoint folder.
"""
