"""Corpus preparation and risk mining on Spark DataFrames."""
