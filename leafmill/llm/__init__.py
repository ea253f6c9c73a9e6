"""Operators for building training corpora: dedup, filtering, extraction, packing, sharding."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so that these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
