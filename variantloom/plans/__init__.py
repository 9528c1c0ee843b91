"""Configurations and whole pipelines."""
