"""Territorial housing analytics as PySpark DataFrame operators."""
