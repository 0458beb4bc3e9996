"""Ordered-changelog analytics on Spark: bind, filter, assemble, transport and materialise change streams."""

__version__ = "0.1.0"
