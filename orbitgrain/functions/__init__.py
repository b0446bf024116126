"""Columns: predicates, scalar functions, masks and indices."""
