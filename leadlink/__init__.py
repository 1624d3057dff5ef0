"""PySpark-native record linkage and attribution."""
