"""Sources and sinks: parquet tables, folders of files, JSON and CSV manifests."""
