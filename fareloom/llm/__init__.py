"""Operators for pipelines of training text."""
