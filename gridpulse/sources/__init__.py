"""Text ingest, the Parquet lake and profiles."""
