"""Trade-tape analytics on Spark DataFrames."""
