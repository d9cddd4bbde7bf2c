"""Grid-job monitoring analytics on Spark: every operator maps DataFrames to DataFrames."""
