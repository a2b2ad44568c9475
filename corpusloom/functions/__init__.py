"""Column expressions: text, dates, view counts, prompts and vectors."""
