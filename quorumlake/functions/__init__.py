"""Column functions: text, values, stemming and similarity."""
