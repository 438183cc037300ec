"""PySpark-native curation of large corpora of tables."""
