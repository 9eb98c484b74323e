"""Streams: windows with late rows, and keyed state in versioned tables."""
