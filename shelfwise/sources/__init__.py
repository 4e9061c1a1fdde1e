"""Readers, writers, schemas and reference tables."""
