"""Readers of the lake and of landed files."""
