"""Spark-native engine for archives of semi-structured records."""

__version__ = "0.1.0"
