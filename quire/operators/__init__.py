"""Operators of the page-text engine."""
