"""DuckDB SQL equivalents of the registered jobs (the correctness oracle)."""
