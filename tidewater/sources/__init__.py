"""Readers and writers for files, logs and layered tables."""
