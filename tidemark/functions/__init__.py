"""Column-level helpers: numbers, dates, text, JSON."""
