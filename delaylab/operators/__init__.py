"""DataFrame operators: features, aggregates, joins, lookups, ordering, learning."""
