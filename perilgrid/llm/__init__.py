"""Corpus preparation operators: one module per operator, queries in ``queries``."""
