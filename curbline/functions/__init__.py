"""Column-level helpers: expressions, predicates, airport boxes, rolled-up measures."""
