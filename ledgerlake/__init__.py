"""Batch analytics for multi-currency transactions and change feeds, on Spark DataFrames."""
