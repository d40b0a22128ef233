"""Composite jobs and their application to the standard tables."""
