"""Column expressions: text, classification, money."""
