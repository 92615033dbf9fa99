"""Column functions: text, time, variant access and format predicates."""
