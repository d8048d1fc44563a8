"""Scoring of unbounded input with a fitted predictor."""
