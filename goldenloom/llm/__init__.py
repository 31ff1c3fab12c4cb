"""Operators for training-data pipelines. Nothing else in goldenloom imports this subpackage."""
