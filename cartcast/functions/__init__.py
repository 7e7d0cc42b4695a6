"""Column-level building blocks (months, statistics, scalar helpers)."""
