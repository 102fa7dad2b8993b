"""Spark-native rule scoring, catalog classification and record preparation."""
