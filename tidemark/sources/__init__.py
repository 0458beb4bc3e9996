"""Changelog sources."""
