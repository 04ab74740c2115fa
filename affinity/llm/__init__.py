"""Operators of a training-data pipeline (see the README for the list and methods)."""
