"""Operators for training-data pipelines. Nothing else in millrace imports this subpackage."""
