"""Readers, writers and named SQL files."""
