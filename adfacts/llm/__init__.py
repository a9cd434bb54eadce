"""Operators for preparing training text; see each module for its method and edge cases."""
