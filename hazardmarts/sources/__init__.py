"""Readers of landed snapshots and of the dimension."""
