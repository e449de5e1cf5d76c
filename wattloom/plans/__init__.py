"""Whole runs: extract, transform, alarms, load."""
