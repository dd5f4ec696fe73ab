"""Column-level helpers: calendar (month bounds, ISO dates) and scalar formatting/casting."""
