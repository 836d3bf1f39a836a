"""Table operators: deduplication, lookups, reports, ranking, integrity, splitting."""
