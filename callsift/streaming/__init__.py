"""Structured Streaming versions of redaction and budget metering."""
