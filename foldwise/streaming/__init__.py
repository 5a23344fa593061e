"""Structured Streaming scoring of a trained bundle."""
