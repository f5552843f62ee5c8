"""Column functions: keys, clock, numbers and nested values. All are built-in expressions."""
