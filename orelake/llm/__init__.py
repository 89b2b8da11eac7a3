"""Operators of a training-data pipeline over document, page and vector tables."""

import sys

from pyspark import cloudpickle

# What tasks run is sent with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
