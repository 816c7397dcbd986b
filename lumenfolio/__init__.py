"""Spark-native engine for aligning, repairing and auditing text corpora."""
