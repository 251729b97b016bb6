"""Scalar text functions."""
