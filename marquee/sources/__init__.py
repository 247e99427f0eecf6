"""Sources and sinks: conform layer over the test tables, JSON landing
files, and versioned Parquet snapshots."""
