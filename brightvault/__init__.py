"""Spark-native product-analytics warehouse."""
