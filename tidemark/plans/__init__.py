"""Compositions of operators: the query registry, its SQL twins and the full pipeline."""
