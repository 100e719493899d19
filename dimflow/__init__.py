"""Batch engine for customer, plan and activity data on Spark DataFrames."""
