"""Entity-history analytics on Spark DataFrames."""
