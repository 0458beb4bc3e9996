"""Changelog plans."""
