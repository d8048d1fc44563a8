"""Readers for the three-file text layout, delimited and libsvm files, and sinks."""
