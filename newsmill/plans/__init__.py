"""Longer plans built from the operators, and the catalogue of queries."""
