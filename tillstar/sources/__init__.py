"""Sources and sinks: Parquet tables, raw CSV, JDBC edges, snapshots and model files."""
