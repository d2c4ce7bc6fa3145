"""Column expressions: dates, numbers, fixed lookups."""
