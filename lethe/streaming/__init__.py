"""Continuous intake, suppression and audit rates on Structured Streaming."""
