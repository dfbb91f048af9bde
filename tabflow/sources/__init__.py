"""Table reads and writes: catalog tables or parquet paths, staged versions, properties."""
