"""The queries of the engine; importing the package registers them all."""

from . import alignments, calls, clustering, folds, learning, relational, rules, scans, selections, sources  # noqa: F401
