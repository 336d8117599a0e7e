"""Column expressions: text, address, classification, date and coordinate rules."""
