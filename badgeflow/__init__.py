"""Badge-event pipeline and analytics on Spark DataFrames."""
