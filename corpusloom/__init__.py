"""Corpus preparation as Spark jobs: read, clean, format, mix, encode, shuffle, pack, report."""

import sys

from pyspark import cloudpickle

# Arrow functions and data sources run in Python workers; shipping them by value spares
# the cluster an installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
