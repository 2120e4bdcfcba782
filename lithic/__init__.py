"""Layered warehouse loading for messy tabular input, written as Spark DataFrame jobs."""
