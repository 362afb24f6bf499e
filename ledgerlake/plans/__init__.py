"""Whole jobs: readers, operators and writers put together."""
