"""Layouts, products, tensor, graph and comparison operators."""
