"""Column expressions: exact money arithmetic and the business rules."""
