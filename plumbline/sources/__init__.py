"""Readers, writers and the landing inventory."""
