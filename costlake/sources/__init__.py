"""Readers, validators and writers."""
