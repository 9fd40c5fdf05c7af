"""Whole jobs: normalization, derivation, release."""
