"""Changelog functions."""
