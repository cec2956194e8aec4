"""Operators for large-scale training data, one module each.

Nothing outside this subpackage imports it.  All of them keep text processing in
Arrow batches (``mapInArrow``) or in built-in expressions, and shuffle fixed-size
keys rather than texts wherever the method allows it.
"""
