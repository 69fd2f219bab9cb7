"""Operators for large text corpora (training-data preparation) on Spark.

Nothing outside this package imports it; ``catalog`` lists its queries.
"""
