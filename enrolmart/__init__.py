"""enrolmart: enrollment-snapshot analytics expressed as Spark DataFrame plans."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel by value, so executors
# need the package neither installed nor on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
