"""Replicating and auditing message logs with Spark DataFrames and streams."""
