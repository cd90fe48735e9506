"""newsloom: a PySpark-native engine that turns mixed-quality news items into ranked events."""
