"""Readers, partition handling and writers."""
