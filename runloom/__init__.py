"""Run catalogs and linked sequencing metadata on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with the job, so executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
