"""Column expressions: text, scores, dates and display formats."""
