"""Operators on bar tables."""
