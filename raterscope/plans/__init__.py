"""Composite jobs: layout normalisers, reports, roll-ups, catalogues, daily run."""
