"""Reading and writing: parquet tables, rule files and raw HTML pages."""
