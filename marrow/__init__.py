"""Spark-native analytics over structured extractions from free text."""
