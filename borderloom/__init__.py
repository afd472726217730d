"""Spark-native matching of line networks across a shared border."""
