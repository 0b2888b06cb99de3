"""Column functions: exact money arithmetic, geohash cells, message formats."""
