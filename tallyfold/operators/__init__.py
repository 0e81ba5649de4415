"""Frame functions: shaping, labels, joins, aggregates, features, comparison."""
