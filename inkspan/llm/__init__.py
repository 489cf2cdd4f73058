"""Operators of a training-data pipeline. Nothing else in the package imports this subpackage."""
