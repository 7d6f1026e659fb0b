"""Trip analytics on Spark DataFrames."""
