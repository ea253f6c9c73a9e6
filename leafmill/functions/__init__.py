"""Column expressions the operators are made of."""
