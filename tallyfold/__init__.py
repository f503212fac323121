"""Complex-survey estimation on Spark DataFrames."""
