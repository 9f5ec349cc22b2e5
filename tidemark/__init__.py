"""Tidemark: a Spark-native toolkit for partitioned market-data lakes."""

__version__ = "0.1.0"
