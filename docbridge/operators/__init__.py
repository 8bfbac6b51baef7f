"""Operators of the write path: outcomes, shipping, the sink."""
