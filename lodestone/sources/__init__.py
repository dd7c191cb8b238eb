"""Readers and writers: bronze JSON documents, silver and mart Parquet tables."""
