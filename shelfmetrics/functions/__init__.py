"""Column-level building blocks: metrics, grading ladders, day ranges, joins."""
