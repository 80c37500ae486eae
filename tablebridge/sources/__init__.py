"""Readers: document collections, files and SQL tables."""
