"""Composed user-level plans: the feature builders and the scoring flow."""
