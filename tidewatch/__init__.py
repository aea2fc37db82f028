"""Event-stream analytics on PySpark: every operator is DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions and processors with the job, so nothing has
# to be installed on the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
