"""Field-asset sync and analytics jobs on Spark DataFrames."""
