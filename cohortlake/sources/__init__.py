"""CSV inputs, layered Parquet tables and stored reports."""
