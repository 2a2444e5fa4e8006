"""Check workload: trace events derived from the given tables, and the same results in SQL."""
