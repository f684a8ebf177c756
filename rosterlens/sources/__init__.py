"""Readers, the directory corpus and its contracts."""
