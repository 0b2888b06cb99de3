"""Readers: message streams, landed JSON, partitioned tables."""
