"""Partitioned logs, lookups, and the two ways a table is written."""
