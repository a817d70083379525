"""DataFrame operators: projections, joins, aggregates, curves, features, models."""
