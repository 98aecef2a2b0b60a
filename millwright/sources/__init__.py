"""Raw input, stored tables and load checks."""
