"""Whole jobs, and the queries the operators are checked with."""
