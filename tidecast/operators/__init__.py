"""Operators on panels: functions from DataFrame to DataFrame."""
