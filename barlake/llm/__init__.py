"""Operators that prepare training text: de-duplication, filters, mixing, formats.

Each module holds one operator with a general interface. ``queries`` registers
them over the given tables. Nothing outside this folder imports it.
"""
