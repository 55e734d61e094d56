"""DataFrame operators; every one takes and returns DataFrames with column names as arguments."""
