"""Spark-native data work around a SQL warehouse and its neighbouring stores."""
