"""Training-data operators: scans, joins, packing, scoring and counting over text tables."""
