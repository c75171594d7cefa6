"""Road-incident analytics on PySpark: load, normalise, keep current, report."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need PyArrow but
# not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
