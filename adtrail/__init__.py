"""Marketing attribution analytics on Spark DataFrames."""
