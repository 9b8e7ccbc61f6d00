"""Operators: pure functions from frames to frames."""
