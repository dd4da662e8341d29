"""Queries over the given tables and the SQL that repeats them."""
