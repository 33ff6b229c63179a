"""Queries over the given tables, built from the operators, each with the SQL that states its result."""
