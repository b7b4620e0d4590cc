"""Structured Streaming forms of the ordered scans."""
