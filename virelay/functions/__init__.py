"""Column expressions on reads and table cells."""
