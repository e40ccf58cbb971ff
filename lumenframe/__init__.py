"""Spark-native dataset-catalog analytics."""
