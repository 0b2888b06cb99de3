"""Fleet-operations analytics as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Small per-batch helpers travel inside the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
