"""Retail invoice-line analytics expressed as Spark DataFrame transformations."""
