"""Readers for the published raw formats, and the writers for the results."""
