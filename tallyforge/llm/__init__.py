"""Training-data operators that learn from, link or compare text. Nothing outside this package imports it."""
