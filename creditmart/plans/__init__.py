"""Whole jobs: the layer backfill, dataset preparation, and the named reports."""
