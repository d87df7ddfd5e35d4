"""Thermal water-stress analytics as Spark DataFrame transformations."""
