"""DataFrame operators: columns, filters, joins, aggregates, deduplication and profiles."""
