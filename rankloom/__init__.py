"""rankloom: team ratings and record linkage as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel with their code, so workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
