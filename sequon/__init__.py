"""Patterns in keyed event data, on Spark tables and streams."""

import sys

from pyspark import cloudpickle

# Tasks carry the functions of this package with them, so that Python workers need
# no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
