"""Structured Streaming: documents as they arrive, and windows over events."""
