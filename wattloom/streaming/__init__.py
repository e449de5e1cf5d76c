"""Incremental runs on Structured Streaming.

Streams carry TIMESTAMP under a UTC session, as watermarks need it; stored tables keep naive time.
"""
