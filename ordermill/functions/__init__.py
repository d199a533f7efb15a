"""Column expressions: text, numbers, units, dates."""
