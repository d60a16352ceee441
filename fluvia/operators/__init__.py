"""Operators over pixel tables (row, col, ...), sites and points."""
