"""Column expressions: text, dates, numbers and change predicates. No Python UDFs."""
