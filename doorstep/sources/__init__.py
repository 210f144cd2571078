"""Readers and writers: CSV, JSON, Parquet, tables and views."""
