"""Files to DataFrames."""
