"""Page-by-page property listing and facility analytics on Spark DataFrames."""
