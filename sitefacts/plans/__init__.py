"""Joins and whole flows."""
