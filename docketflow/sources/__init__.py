"""Table schemas, readers and result tables."""
