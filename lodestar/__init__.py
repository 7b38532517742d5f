"""Search and ranking analytics on Spark DataFrames."""
