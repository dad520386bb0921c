"""Training-data operators. Nothing else in the library imports this package.

The functions that run inside tasks are pickled by value, so executors need
neither this repository on their path nor a copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
