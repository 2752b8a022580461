"""Operators over catalogue tables."""
