"""Column expressions: cleaning and model features."""
