"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; the driver contract adds
its queries only when it is present.
"""
