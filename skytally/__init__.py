"""Analytics over aircraft position reports on Spark DataFrames and Structured Streaming."""
