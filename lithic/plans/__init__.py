"""The warehouse itself: schemas, layer loads, the full run and the reports."""
