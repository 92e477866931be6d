"""Measurement and maintenance analytics expressed as Spark DataFrame plans."""
