"""Storage: versioned tables, append-only logs, day-partitioned marts, file-system lookups."""
