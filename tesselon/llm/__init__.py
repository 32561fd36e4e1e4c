"""Operators for preparing large training data. Nothing else in the package imports this."""
