"""Operators for preparing training data: one module each, their queries and SQL in ``queries``."""
