"""Operators for preparing training text, each with a general interface; ``queries`` applies them to the given tables."""
