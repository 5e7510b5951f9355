"""Operators for preparing training text: de-duplication, filters, search, mixing, tokenizing.

Nothing else in the library imports this subpackage.
"""
