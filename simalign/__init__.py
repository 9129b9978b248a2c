"""Document similarity classification and time-series alignment on Spark DataFrames."""
