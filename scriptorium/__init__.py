"""Scriptorium: a PySpark-native engine for libraries of scanned and digital books."""

__version__ = "0.1.0"
