"""Retail price declarations on Spark: bronze, silver, marts and gold as DataFrame functions."""
