"""Reading tabs, storing layer tables, and the shared folder for intermediate data."""
