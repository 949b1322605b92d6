"""Household power analytics as Spark DataFrame transformations."""
