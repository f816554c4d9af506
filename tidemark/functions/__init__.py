"""Column expressions and the aggregate, scalar and table functions registered for SQL."""
