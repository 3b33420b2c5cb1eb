"""Sources and sinks: parquet tables, CSV files, spreadsheet workbooks."""
