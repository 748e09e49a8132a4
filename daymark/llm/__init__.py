"""Operators of a training-data pipeline. Nothing outside this package imports it; the registry does if it is there."""
