"""Catalogue reconciliation and data quality on Spark DataFrames."""
