"""Column expressions: dates and status codes."""
