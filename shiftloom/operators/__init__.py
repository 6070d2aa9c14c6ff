"""Joins, merges, windows and roll-ups that the loaders are put together from."""
