"""Lontar: a PySpark-native engine that turns raw collected text into curated corpora."""
