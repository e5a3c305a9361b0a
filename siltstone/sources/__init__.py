"""Readers of files, records and manifests, and writers."""
