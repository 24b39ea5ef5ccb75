"""Readers and writers of the library's inputs and tables."""
