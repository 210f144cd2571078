"""Jobs composed of operators, and the registry of queries with their SQL twins."""
