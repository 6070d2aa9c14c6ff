"""Column functions: text, clock and calendar arithmetic, guarded parsing."""
