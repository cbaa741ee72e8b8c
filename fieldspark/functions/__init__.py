"""Column functions: scores, bands, parameter maps and text."""
