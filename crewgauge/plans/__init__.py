"""Silver, gold, study and reporting plans. Functions take and return lazy DataFrames."""
