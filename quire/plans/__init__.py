"""Plans of the page-text engine."""
