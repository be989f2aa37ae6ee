"""Raw tables: CSV or Parquet extracts, and the ones derived from the test tables."""
