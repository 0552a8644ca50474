"""Queries over the driver tables: packet feeds made from them, and the queries with their SQL twins."""
