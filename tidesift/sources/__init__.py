"""Readers, writers, the shared scratch folder and the fixed word tables."""
