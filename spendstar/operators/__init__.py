"""Layer operators: silver, keys, dimensions, fact, quality, reconciliation, marts."""
