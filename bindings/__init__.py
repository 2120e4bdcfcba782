"""The operators bound to the driver's tables, each with SQL that computes the same result."""
