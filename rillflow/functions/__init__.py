"""Column expressions: parsing, event time, keys and small value helpers."""
