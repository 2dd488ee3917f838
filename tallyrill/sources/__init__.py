"""Readers with declared schemas, and writers."""
