"""Sluiceway: a PySpark-native engine that builds and queries a bibliographic inventory."""

__version__ = "0.1.0"
