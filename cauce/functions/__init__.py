"""Column expressions: text, casts, dates and code maps. Nothing here runs Python per row."""
