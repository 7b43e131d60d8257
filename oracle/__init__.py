"""SQL counterparts of the Spark plans for DuckDB, written on their own."""
