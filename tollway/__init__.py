"""Checkpoint-traffic analytics on Spark DataFrames."""
