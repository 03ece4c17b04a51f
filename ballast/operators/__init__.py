"""The rebalancing operators; each takes and returns DataFrames."""
