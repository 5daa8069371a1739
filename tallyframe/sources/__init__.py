"""Readers: Parquet tables, delimited files, JDBC tables and JSON payloads."""
