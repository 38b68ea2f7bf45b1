"""Health-plan claims jobs on Spark DataFrames."""
