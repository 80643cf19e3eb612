"""Part of the kinfold engine."""
