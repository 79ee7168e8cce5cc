"""Operators for preparing training data: each in a module of its own, with its query and SQL in ``queries``."""
