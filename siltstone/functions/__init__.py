"""Column functions: text, vectors and identifiers."""
