"""Scoring and alerting on transaction streams."""
