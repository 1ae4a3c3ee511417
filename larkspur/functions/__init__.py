"""Column functions: text, arrays, dates."""
