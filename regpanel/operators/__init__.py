"""DataFrame operators (projection, joins, aggregation, windows, reshape,
ordering, set operations, profile)."""
