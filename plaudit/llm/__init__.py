"""Operators of a training-data pipeline: one module each, their named queries in `queries`."""
