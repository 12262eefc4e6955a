"""Feature, retrieval and lineage operators written as PySpark DataFrame code."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so executors need neither
# this package nor the Spark ML imports of the modules the functions live in.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
