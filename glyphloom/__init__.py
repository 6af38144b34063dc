"""Spark-native analytics over grounded text-in-image question answering data."""

__version__ = "0.1.0"
