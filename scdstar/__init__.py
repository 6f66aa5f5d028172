"""Spark-native SCD-2 warehouse and star-schema loader for airline data."""
