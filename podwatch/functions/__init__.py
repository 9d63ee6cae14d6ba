"""Column helpers: time, text and JSON payload expressions."""
