"""Reusable DataFrame operators the extracts are built from."""
