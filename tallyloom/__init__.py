"""Word, co-occurrence, index, graph and event analytics on Spark DataFrames."""
