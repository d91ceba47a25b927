"""Spark-native analytics for factory machines and after-sales service records."""
