"""Structured Streaming over a folder of landed snapshots."""
