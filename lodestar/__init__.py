"""Lodestar: star-schema loading on Spark DataFrames."""
