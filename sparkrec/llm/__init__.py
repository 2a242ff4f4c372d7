"""Operators for preparing training data, and the queries registered for them."""
