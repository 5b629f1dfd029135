"""Declarative plans: which data, which steps."""
