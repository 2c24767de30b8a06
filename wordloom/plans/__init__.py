"""Whole jobs: paths in, paths out."""
