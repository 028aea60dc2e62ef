"""Checks of the library against the generated test tables."""
