"""Plan helpers: joins on one row per key or null-safe keys, percentiles from counts."""
