"""Composite jobs: silver, gold, features, models, and the driver-table mapping."""
