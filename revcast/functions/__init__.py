"""Column expressions: fiscal calendar, null semantics, business rules."""
