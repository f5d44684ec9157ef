"""Relational operators of the edit layers, each a DataFrame -> DataFrame function."""
