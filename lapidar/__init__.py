"""Spark-native analytics over structured regulatory documents and text corpora."""
