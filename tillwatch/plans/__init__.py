"""Whole programs and the registered queries with their SQL counterparts."""
