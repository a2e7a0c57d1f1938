"""Reading the wide input and writing or reading result tables."""
