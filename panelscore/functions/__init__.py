"""Column-level helpers (pure Column expressions, no Python on the row path)."""
