"""Recommendation-data engine on Spark DataFrames, SQL and Structured Streaming."""
