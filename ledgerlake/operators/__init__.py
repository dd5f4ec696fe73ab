"""Reusable DataFrame operators: as-of joins, size-checked broadcasts, upsert, newest batch, extremes, chunks."""
