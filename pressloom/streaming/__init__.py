"""Continuous intake, duplicate suppression and extraction."""
