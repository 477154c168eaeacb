"""Queries: operators composed over the input tables, with their oracle SQL."""
