"""Named queries over a folder of Parquet tables, each with its DuckDB equivalent where SQL has one."""
