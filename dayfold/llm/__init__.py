"""Operators for training-data pipelines: one module each, their queries and SQL twins beside them."""
