"""threadlens: threaded-discussion analytics as plain PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that no copy of it has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
