"""oreflow: table and stream mining operators written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python tasks travel with the task, so that executors
# need numpy, pandas and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
