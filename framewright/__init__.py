"""Spark-native analytics for frame-indexed tracking metadata."""

__version__ = "0.1.0"
