"""Compositions of the operators."""
