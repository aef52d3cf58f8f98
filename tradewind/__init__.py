"""Spark-native commerce analytics: star schema, marts, business rules, quality, history, streams."""
