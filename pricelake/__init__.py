"""Retail price and promotion lakehouse engine on PySpark."""
