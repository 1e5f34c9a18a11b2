"""Quire: page-oriented text analytics expressed as PySpark DataFrame programs."""
