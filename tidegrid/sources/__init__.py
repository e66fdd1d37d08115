"""Readers, writers and file-level facts."""
