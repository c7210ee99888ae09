"""Column functions: scalars, paths and predicates."""
