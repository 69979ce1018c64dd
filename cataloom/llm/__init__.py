"""Operators of a large-scale training-data pipeline.

One module per operator, ``queries`` registers them.  Functions that run in
Python workers are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
