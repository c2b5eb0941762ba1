"""Price-transparency analytics on Spark DataFrames."""
