"""Distributed operators: profiling, splits, preparation, models and metrics."""
