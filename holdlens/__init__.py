"""Spark-native analytics over fund holdings and market series."""
