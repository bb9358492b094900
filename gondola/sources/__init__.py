"""Readers: nested archives, pipe-delimited files, Parquet tables, portal pages."""
