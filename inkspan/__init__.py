"""Document analytics on Spark: DataFrames in, DataFrames out."""
