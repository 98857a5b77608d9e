"""Relational, window, quality, dimensional, usage, policy and retrieval operators."""
