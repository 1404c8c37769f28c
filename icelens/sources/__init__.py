"""Readers and writers: landed feeds, partitioned tables, views over the driver tables."""
