"""Operators for preparing training data at corpus scale (op1 to op10) and their queries.

Nothing else in the library imports this subpackage.
"""
