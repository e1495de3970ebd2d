"""Operators for large training-data pipelines, and their driver queries."""
