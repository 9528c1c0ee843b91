"""Readers and writers of cell tables."""
