"""Column expressions: text, numbers, dates, links and similarity."""
