"""DataFrame-to-DataFrame operators: scans, joins, dimensions, profiles."""
