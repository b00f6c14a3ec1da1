"""Readers, writers and configuration."""
