"""Occupational-risk analytics expressed as PySpark DataFrame plans."""
