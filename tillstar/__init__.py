"""Retail centralisation and sales analytics as lazy Spark DataFrame plans."""

__version__ = "0.1.0"
