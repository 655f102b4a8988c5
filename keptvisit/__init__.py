"""Longitudinal clinic-retention analytics on Spark DataFrames."""
