"""Fiscal-calendar sales-operations analytics on Spark DataFrames."""
