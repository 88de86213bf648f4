"""Operators over cleaned listens: each a function DataFrame -> DataFrame."""
