"""Commerce analytics as plain PySpark DataFrame functions."""
