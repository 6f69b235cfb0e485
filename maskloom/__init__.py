"""Spark-native preparation, synthesis and assessment of sensitive tables."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The helpers that run on Arrow blocks travel with their task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
