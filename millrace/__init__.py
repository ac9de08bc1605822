"""Millrace: moving and shaping tables with Spark DataFrames, in batch and as streams."""
