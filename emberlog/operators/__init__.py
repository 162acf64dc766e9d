"""Table operators: windows, joins, aggregates, models, drift."""
