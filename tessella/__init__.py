"""Spark-native building, resuming, auditing and analysing of labelled corpora."""
