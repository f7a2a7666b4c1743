"""Column expressions: text, dates, period coverage, URLs, HTML and file identity."""
