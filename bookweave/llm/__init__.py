"""Operators for large training-text corpora, one module each, and their queries."""
