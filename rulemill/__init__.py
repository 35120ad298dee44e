"""Data-quality and AI-data operators as PySpark DataFrame functions."""

__version__ = "0.1.0"
