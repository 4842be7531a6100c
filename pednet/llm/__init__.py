"""Operators for preparing training text at scale: deduplication, mixing, packing, search and rules.

Nothing else in the library imports this subpackage.
"""
