"""Column expressions: casts, hashing, measures, rounding, calendar attributes."""
