"""salesloom: dimensional sales and profit analytics on Spark DataFrames."""
