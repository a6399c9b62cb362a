"""Readers and writers, and the flattening of source payloads into lead rows."""
