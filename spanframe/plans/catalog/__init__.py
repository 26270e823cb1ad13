"""Registered queries, one module per area of the operator inventory."""

from . import (  # noqa: F401
    basics,
    frames,
    spans,
    metrics,
    series,
    vocab,
    vectors,
    sampling,
    io,
    models,
)
