"""Column functions and declared schemas."""
