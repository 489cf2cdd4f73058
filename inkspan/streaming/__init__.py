"""Streams of file requests and of processing state."""
