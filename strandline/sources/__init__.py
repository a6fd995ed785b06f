"""Sources: text formats read as DataFrames."""
