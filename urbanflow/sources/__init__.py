"""Batch and stream readers."""
