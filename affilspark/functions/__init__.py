"""Column functions: text normalization, keys, dates and identifiers."""
