"""Interval-keyed genomic analytics on Spark DataFrames."""
