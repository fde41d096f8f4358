"""Bindings to the benchmark tables, registered queries and their SQL counterparts."""
