"""Change-stream analytics for device fleets, on Spark DataFrames and Structured Streaming."""
