"""Stored tables: upserts, events, alarms and their files."""
