"""Reading and writing tables: CSV, parquet, marts, the event feed."""
