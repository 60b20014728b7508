"""Column functions: text, address, name and rule expressions."""
