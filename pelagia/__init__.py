"""Species-occurrence and taxonomy analytics on Spark DataFrames."""
