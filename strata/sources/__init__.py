"""Readers for the raw and curated zones, and path helpers."""
