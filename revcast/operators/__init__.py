"""Generic DataFrame operators: joins, projections, aggregates, dedup, sets."""
