"""Typed errors raised by readers and planners."""


class DataFormatError(ValueError):
    """A file does not follow the dense, sparse or target layout."""


class EmptyDataError(ValueError):
    """Features or target hold no rows."""


class RowMismatchError(ValueError):
    """Features and target hold different numbers of rows."""


class TargetError(ValueError):
    """The target cannot be used for the requested task."""


class NoModelError(RuntimeError):
    """Every candidate failed."""


class ConvergenceError(RuntimeError):
    """A fit missed its tolerance."""


class DeadlineError(RuntimeError):
    """The time budget of a search is over."""
