"""Queries over the driver tables, one per operator, with their SQL counterparts."""
