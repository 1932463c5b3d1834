"""Relationship-graph risk features for loan applications, on PySpark."""
