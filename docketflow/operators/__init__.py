"""Joins, lookups, exit resolution, log differences and clean-up filters."""
