"""Order-delivery analytics and prediction on Spark DataFrames."""
