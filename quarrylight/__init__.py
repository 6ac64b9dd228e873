"""Spark-native entity enrichment analytics: DataFrame operators, sources, functions, plans and streams."""
