"""Streaming form of the update step."""
