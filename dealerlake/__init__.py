"""Sales and after-sales warehouse built on Spark DataFrames."""
