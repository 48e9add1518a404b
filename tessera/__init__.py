"""Grounded retrieval and data preparation as Spark DataFrames."""
