"""Part of the kinfold engine."""

import sys

from pyspark import cloudpickle

# What runs on executors travels with the task: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
