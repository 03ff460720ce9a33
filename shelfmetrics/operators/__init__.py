"""Report operators: pure DataFrame to DataFrame functions."""
