"""Column expressions: cleaning, payload parsing, quality metrics."""
