"""Tidemark: a Spark-native engine for semi-structured public notices."""

__version__ = "0.1.0"
