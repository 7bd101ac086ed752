"""Operators that prepare training data from text tables."""
