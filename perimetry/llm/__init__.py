"""Operators for building training data: one module per operator, each usable on its own."""
