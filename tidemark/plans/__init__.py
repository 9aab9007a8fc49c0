"""Document projections and search queries."""
