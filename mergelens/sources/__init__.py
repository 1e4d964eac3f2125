"""Readers of landed pages and envelopes, and writers of results."""
