"""DataFrame -> DataFrame operators: reshape, keys and sets, joins, dimensions."""
