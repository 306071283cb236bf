"""Column helpers: exact fixed-point arithmetic, calendar months, small lookups."""
