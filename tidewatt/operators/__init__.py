"""Reusable DataFrame operators; the query faces are built from them."""
