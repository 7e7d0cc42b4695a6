"""Relational operators of the feature/scoring flow, each DataFrame in, DataFrame out."""
