"""Spark-native document-corpus analytics."""
