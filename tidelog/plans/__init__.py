"""Queries over the given tables: shaped inputs, registered queries and their SQL twins."""
