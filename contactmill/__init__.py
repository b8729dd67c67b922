"""contactmill: contact clean-up and corpus preparation on Spark DataFrames."""
