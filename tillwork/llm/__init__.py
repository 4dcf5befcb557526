"""Operators for training-data pipelines over corpora. Nothing else in the library imports this."""
