"""Independent SQL for every registered query."""
