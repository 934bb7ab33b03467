"""Readers and writers of the raw, cleaned and dimensional layers."""
