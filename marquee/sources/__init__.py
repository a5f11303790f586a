"""Reading and storing tables."""
