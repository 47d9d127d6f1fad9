"""Operators for building training text."""
