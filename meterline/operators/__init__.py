"""Operators: functions from DataFrame to DataFrame with explicit parameters and no clock reads."""
