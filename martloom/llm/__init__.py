"""Operators for preparing training text: one module each, Spark jobs over whole tables.

Nothing outside this folder imports it. Functions that run inside tasks are
pickled by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
