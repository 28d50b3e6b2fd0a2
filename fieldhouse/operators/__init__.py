"""DataFrame-to-DataFrame operators: features, targets, joins, backtests, metrics."""
