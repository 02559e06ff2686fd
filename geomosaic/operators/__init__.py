"""DataFrame operators: catalog, joins, space, aggregates, mosaics, pixels, quality."""
