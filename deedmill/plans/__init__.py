"""Composed jobs: extract, dimensional model, validation, roll-ups, backfill."""
