"""Queries over the given tables, one per operator, and SQL that must agree with them."""
