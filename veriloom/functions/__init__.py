"""Column expressions: no jobs, no shuffles, everything stays in generated code."""
