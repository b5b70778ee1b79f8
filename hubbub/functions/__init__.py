"""Column functions: text, times and addresses."""
