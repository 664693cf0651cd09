"""Readers, writers and checks on landed files."""
