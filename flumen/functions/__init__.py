"""Scalar recipes as Column expressions."""
