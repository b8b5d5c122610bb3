"""Sources: warehouse scan, Hive read-back, file inventory, synthetic sales."""
