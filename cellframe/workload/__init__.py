"""Matrices, vectors, tensors and graphs over the driver tables, and the queries on them."""
