"""Sources and sinks: raw-table schemas, CSV ingest, the test-table role
mapping, Parquet/CSV/JSON writers and the per-session star store."""
