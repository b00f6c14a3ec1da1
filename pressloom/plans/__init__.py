"""Whole jobs: extract, curate, merge, collect; and the catalogue of site rules."""
