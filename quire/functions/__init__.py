"""Functions of the page-text engine."""
