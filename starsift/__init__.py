"""Product-review analytics as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Helpers used inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
