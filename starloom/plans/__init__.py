"""Compositions of operators driven by specs."""
