"""Readers for landed files: each has a parse step on rows and a read step on paths."""
