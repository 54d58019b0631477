"""Operators on wide and long frames."""
