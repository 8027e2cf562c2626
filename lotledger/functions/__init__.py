"""Column -> Column functions: text, claims and numeric features."""
