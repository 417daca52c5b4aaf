"""Event ingestion on Spark: DataFrame operators for batch and streaming."""
