"""Workload analytics for database trace events, on PySpark DataFrames."""
