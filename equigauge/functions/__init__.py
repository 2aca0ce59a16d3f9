"""Column-level helpers and fixed code tables."""
