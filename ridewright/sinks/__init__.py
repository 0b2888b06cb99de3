"""Writers: keyed upsert, expiring rows, message topics, export projections."""
