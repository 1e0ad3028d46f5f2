"""DataFrame operators: deduplication, ranking, dimensions, checks, reconciliation, measures."""
