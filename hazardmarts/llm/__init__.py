"""Operators for building training data: scoring, filtering, formatting, deduplication, mixing."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of these operators with them, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
