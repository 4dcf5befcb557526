"""Retail analytics on Spark: reports, exploration, data quality, streams and models."""
