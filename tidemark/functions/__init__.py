"""Column expressions with the exact null, tie, rounding and boundary rules of the models."""
