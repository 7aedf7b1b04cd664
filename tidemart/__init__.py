"""Spark-native analytics for marketplace event data."""
