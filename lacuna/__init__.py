"""Missing-data profiling, filling and auditing on Spark DataFrames."""
