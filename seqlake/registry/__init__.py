"""Registered queries, the tables they derive, and equivalent SQL."""
