"""Operators: partitioned export, date replacement, table DDL, metrics, sequential baseline."""
