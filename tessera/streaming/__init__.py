"""Structured Streaming variants: triggered (availableNow) file streams feeding the
tagged source, quarantine and history, plus a stream-static temporal join."""
