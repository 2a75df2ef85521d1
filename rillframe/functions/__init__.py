"""Column expressions and hashes."""
