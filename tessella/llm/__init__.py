"""Operators for training-data corpora, each on Spark DataFrames."""
