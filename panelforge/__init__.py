"""Empirical-finance panel analytics as Spark DataFrame transformations."""
