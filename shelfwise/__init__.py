"""Retail analytics as lazy Spark DataFrame operators."""
