"""Document-processing jobs expressed as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors with their code, which need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
