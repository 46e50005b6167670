"""Column helpers: JSON access, tolerant parsing, calendar arithmetic, text."""
