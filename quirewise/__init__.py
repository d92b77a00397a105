"""Quirewise: a PySpark-native engine for document evidence and text corpora."""
