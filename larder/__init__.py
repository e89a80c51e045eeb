"""Larder: feature preparation, clustering and word counts on Spark DataFrames."""
