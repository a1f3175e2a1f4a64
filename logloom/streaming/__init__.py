"""Structured Streaming jobs: assembly with carried-over lines, enrichment with refreshed lookups."""
