"""Candidate rosters, grids, search and the fitted predictor."""
