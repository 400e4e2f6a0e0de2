"""Operators for training-data pipelines, each by a named method (see the module docstrings)."""
