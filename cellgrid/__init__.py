"""Wide-column tables as ordinary DataFrames."""
