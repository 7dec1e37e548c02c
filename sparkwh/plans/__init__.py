"""Table layout, table rewrites, whole jobs, and the registered queries."""
