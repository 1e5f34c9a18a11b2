"""Streaming of the page-text engine."""
