"""Batch analytics over text collections, graphs and star-schema tables on Spark DataFrames."""
