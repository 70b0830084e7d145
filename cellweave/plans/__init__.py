"""Skew plans for keyed work, and the registered queries with their SQL."""
