"""Sources and sinks: CSV, Parquet, catalog tables, upserts, BI exports."""
