"""Relational analytics on PySpark."""
