"""Corpus cleaning and de-duplication operators for PySpark."""
