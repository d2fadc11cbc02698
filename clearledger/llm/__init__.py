"""Operators for preparing training text: packing, de-duplication, scoring, encoding, sharding.

Nothing outside this subpackage imports it.
"""
