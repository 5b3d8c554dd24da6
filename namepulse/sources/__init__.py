"""Readers: record files, sensor files, segment listings, streams, driver tables."""
