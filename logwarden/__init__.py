"""Threat analytics on web access logs, written as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
