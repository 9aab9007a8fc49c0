"""Lake tables, topics and the index catalog."""
