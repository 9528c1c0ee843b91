"""Operators on cell tables and on tables of variants."""
