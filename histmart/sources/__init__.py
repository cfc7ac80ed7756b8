"""Readers for the raw extracts and sinks for versioned tables."""
