"""Column expressions: safe parsing of raw text, and return arithmetic."""
