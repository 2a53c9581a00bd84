"""Column functions: scalars, text, HTML and messages."""
