"""Layered claims analytics on Spark DataFrames."""
