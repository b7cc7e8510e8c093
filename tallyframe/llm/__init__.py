"""Operators for preparing training text: one module for each, bound to tables in ``queries``."""
