"""Spark jobs for curating, scoring and comparing program-generation datasets."""
