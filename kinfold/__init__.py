"""kinfold: Spark-first analytics for grouping very large collections of sequences into families."""

__version__ = "0.1.0"
