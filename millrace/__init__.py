"""A PySpark-native engine for incremental ingestion and analysis of postings and texts."""

import sys

from pyspark import cloudpickle

# functions of this package travel with a job, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
