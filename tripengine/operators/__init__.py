"""DataFrame operators: cleaning, joins, aggregates, profiles, models."""
