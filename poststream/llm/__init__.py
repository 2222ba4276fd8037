"""Operators and queries for preparing training text at scale.

Nothing else in the library imports this subpackage.  ``queries`` registers
one query per operator; each operator module has its own general interface.
"""
