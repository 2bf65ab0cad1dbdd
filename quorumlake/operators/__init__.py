"""DataFrame operators: selection, joins, indexes, search, segments, tables."""
