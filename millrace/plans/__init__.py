"""Inputs derived from the supplied tables, and the table flows built on the operators."""
