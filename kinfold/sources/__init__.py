"""Part of the kinfold engine."""

import sys

from pyspark import cloudpickle

# Data sources travel to the workers that plan and read them: those need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
