"""Operators for large-scale training-data pipelines (one module per operator).

The functions that run inside tasks are shipped by value, so executors need
no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
