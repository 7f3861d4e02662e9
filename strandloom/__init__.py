"""Approximate matching of short sequences into long ones, as Spark DataFrame plans."""
