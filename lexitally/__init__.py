"""Spark-native text counting and run verification."""
