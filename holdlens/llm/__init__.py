"""Operators of a training-data pipeline; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# executors get these functions with the job and need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
