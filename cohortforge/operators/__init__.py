"""Relational building blocks and the composite feature operators."""
