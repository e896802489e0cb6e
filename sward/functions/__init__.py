"""Column expressions: scalar helpers and colour maths."""
