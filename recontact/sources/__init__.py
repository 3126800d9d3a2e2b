"""Table schemas and readers."""
