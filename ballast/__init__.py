"""Portfolio rebalancing on Spark: valuation, allocation, trades, prices, cash and ledger upkeep."""
