"""Quire: manuscript structure analytics on Spark DataFrames."""
