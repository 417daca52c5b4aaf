"""Operators for training-data pipelines over Spark DataFrames."""
