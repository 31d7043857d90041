"""Sluice: a PySpark-native batch analytics engine for semi-structured postings."""
