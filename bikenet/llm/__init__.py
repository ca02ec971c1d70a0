"""Operators for preparing training text: tokens, search, copies, leaks, secrets and scores."""
