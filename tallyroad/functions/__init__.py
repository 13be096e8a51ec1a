"""Column functions: text, JSON, time buckets, status mapping."""
