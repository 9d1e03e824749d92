"""DataFrame operators: cleaning, joins, statistics, thresholds, trips, road graph."""
