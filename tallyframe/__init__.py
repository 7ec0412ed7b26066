"""Spark-native analytics for auditing polling-table tally sheets."""
