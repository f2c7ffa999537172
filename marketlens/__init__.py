"""Catalogue analytics as lazy PySpark DataFrame operators."""
