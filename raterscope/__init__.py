"""Labelling-quality analytics as PySpark DataFrame jobs."""
