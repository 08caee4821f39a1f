"""Operators for training-data corpora: each works on DataFrames of documents or pages and leaves partitioning and shuffles to Spark.

Nothing else in the library imports this package.
"""
