"""Feeding loads from a stream."""
