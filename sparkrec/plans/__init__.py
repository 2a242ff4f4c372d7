"""Registered queries: bindings of the operators to concrete tables."""
