"""Changelog operators."""
