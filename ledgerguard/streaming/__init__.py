"""Structured Streaming versions of the card operators."""
