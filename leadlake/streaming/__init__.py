"""Structured Streaming versions of the bronze and silver layers."""
