"""Multilingual text-corpus curation on Spark DataFrames."""
