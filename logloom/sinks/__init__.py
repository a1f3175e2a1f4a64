"""Typed tables on storage."""
