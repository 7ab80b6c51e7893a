"""Gated storage and the fetch-clean-validate-store pipeline."""
