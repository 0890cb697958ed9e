"""Marginalia: a Spark-first engine for document corpora and cited retrieval."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel with their code, so that Python workers do not need
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
