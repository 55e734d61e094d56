"""Column expressions: calendar parts, day differences, null handling."""
