"""Structured Streaming drivers for change batches."""

from histmart.streaming.change_stream import apply_change_batches, cdc_stream  # noqa: F401
