"""Column encoders."""
