"""Call-audit analytics on Spark DataFrames."""
