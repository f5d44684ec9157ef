"""Readers and writers: landing JSON lines, feed captures, layer tables."""
