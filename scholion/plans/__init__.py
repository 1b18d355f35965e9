"""Whole-table jobs over the driver tables, with their SQL counterparts."""
