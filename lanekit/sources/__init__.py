"""Sources and sinks: parquet/JSON/text scans, table export, restore and
publishing."""
