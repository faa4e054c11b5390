"""Readers for the raw claim, registry, census and reference files."""
