"""tidemark: listing-history analytics on Spark DataFrames."""
