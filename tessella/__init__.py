"""Record linkage for noisy records at cluster scale, written in Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so they need no installed copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
