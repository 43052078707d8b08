"""Measured decisions: how to spread a product, and which product of a chain goes first."""
