"""Whole jobs, panels over the test tables, and the registered queries."""
