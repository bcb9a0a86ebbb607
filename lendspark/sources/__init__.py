"""Readers, writers and audits of raw files."""
