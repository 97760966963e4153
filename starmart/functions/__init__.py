"""Column expressions: conforming rules and exact arithmetic."""
