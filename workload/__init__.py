"""Queries over the given tables, each beside the SQL it must agree with."""
