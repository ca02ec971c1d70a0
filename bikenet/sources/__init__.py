"""Readers. Each takes a session and a path and returns a lazy DataFrame."""
