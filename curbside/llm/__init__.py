"""Operators of a text-corpus pipeline. Nothing else in the library imports this package."""
