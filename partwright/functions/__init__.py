"""Column functions: Hive key escaping, dates and elapsed time."""
