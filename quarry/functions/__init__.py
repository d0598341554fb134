"""Column-expression helpers (pure functions Column -> Column)."""
