"""Composite need scoring and constrained allocation over geographic units, as Spark plans."""
