"""Spark-native engine for discovering sensitive data in documents and tables."""
