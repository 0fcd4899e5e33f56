"""Operators that prepare training text, apart from the event engine."""
