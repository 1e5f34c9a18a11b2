"""Sources of the page-text engine."""
