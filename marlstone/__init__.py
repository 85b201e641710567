"""Marlstone: a Spark-native engine for market-data and news event streams."""

__version__ = "0.1.0"
