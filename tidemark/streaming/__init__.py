"""Changelog streaming."""
