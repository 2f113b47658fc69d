"""A claims-style data quality and analytics engine on Spark DataFrames, SQL and Structured Streaming."""
