"""Mobile-money fraud analytics on Spark DataFrames, MLlib and Structured Streaming."""
