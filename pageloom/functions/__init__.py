"""Column expressions: ``Column -> Column``, all built-in functions."""
