"""Tabular profiling, preparation, model search and scoring on Spark DataFrames."""

from tablewright.operators.metrics import classification_metrics, regression_metrics
from tablewright.plans.predictor import TablePredictor, evaluate, fit
from tablewright.sources.matrix import load_data
from tablewright.sources.target import load_types

__all__ = [
    "TablePredictor",
    "classification_metrics",
    "evaluate",
    "fit",
    "load_data",
    "load_types",
    "regression_metrics",
]
