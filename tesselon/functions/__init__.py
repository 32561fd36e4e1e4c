"""Functions on columns."""
