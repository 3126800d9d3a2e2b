"""Column expressions: text, dates, nested values and protected columns."""
