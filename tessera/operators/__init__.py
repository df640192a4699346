"""Operators of the engine."""
