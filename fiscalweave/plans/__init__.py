"""Bindings to concrete tables, the weekly pipeline and the query registry."""
