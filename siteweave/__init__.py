"""Spark-native record linkage and reconciliation of two tables of physical sites."""
