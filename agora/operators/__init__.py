"""DataFrame operators: raw layer, queries, search, dimensions, scoring."""
