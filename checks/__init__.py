"""Registered queries over the driver tables, their fixtures and their SQL oracles."""
