"""Column expressions: measures, banding, formatting."""
