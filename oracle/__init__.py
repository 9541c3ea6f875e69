"""DuckDB counterparts of the registered queries, written apart from the Spark operators."""
