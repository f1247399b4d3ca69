"""tallyguard: Spark jobs that prepare, label, score and evaluate financial-crime data."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job, so executors need no installation
cloudpickle.register_pickle_by_value(sys.modules[__name__])
