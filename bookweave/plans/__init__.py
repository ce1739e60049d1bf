"""Whole queries put together from the operators, and the SQL that gives the same rows."""
