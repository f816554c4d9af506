"""DataFrame operators: each takes and returns DataFrames, defined on event time with explicit tie-breaks."""
