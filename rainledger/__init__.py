"""Retail and weather lakehouse operators on Spark DataFrames."""
