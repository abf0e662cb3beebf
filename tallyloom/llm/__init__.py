"""Operators for preparing training text, and the queries over them. Nothing else in the library imports this package."""
