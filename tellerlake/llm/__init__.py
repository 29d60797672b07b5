"""Operators of the training-data pipeline, and their queries."""
