"""Readers: bronze/silver/gold Parquet scans, zone CSVs, the source manifest and the
ride-shaped inputs derived from the shared test tables."""
