"""Operators for building training text; nothing outside this subpackage imports it."""
