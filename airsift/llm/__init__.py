"""Operators for preparing training text, each built on Spark jobs over whole tables."""
