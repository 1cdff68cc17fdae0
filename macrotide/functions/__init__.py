"""Column expressions: cleaning, calendar, arithmetic and identifiers."""
