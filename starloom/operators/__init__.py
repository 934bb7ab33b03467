"""DataFrame operators: cleaning, keys, dimensions, facts, checks, run log."""
