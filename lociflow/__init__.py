"""A PySpark-native engine for variant-feature analytics."""
