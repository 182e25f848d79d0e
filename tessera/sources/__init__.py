"""Sources and sinks: parquet scans, staging loads, change feeds, fixture adapters."""
