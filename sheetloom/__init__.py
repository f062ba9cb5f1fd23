"""Catalogue ingestion and requirement matching as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
