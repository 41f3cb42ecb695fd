"""Operators for training-data pipelines: one module per operator, with its registered query."""
