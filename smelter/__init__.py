"""Raw sales files to a star schema in three layers, on plain Spark DataFrames."""
