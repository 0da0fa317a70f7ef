"""Operators over catalogue, series and pattern tables."""
