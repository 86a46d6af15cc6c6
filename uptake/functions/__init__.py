"""Column expressions: the scoring rules, exact arithmetic, labels, calendar."""
