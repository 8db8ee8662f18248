"""Security-event analytics on Spark DataFrames, batch and streaming."""
