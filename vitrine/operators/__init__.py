"""Relational operators of the catalogue, the model registry and the reports."""
