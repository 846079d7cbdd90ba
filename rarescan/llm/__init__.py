"""Operators for training data: one module per operator, `queries` registers them."""
