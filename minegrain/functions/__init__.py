"""Column expressions and skew-safe ordering helpers."""
