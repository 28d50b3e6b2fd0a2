"""Column expressions: odds maths, coercions, calendar and name helpers."""
