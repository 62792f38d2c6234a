"""Order-stream analytics as Spark DataFrames and Structured Streaming queries."""
