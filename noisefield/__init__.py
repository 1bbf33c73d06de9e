"""Ambient-noise correlation analytics on Spark DataFrames."""
