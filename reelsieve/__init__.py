"""Spark-native curation and quality-control engine for large clip and text collections."""
