"""Where the bank's tables come from: catalog, partitioned warehouse, test-data stand-ins; and the run sink."""
