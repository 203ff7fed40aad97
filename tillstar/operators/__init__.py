"""Operators: functions from DataFrame to DataFrame. None runs an action."""
