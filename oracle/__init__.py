"""Independent DuckDB statements for every registered query that SQL can express."""
