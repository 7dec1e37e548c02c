"""Scalar expressions and distributed numbering."""
