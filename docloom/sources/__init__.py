"""Readers, writers and change sets."""
