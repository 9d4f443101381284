"""Column functions: text, URLs, titles."""
