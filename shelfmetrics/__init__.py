"""E-commerce report tables as PySpark DataFrame functions."""
