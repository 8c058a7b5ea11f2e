"""Readers and writers for raw documents, typed tables and configured tables."""
