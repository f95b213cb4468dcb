"""Readers, writers and the layout of the lake."""
