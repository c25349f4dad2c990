"""Down-sampling of sensor readings with Spark DataFrames and Structured Streaming."""
