"""Operators for preparing training data. Nothing else in the library imports this package.

Functions that run inside tasks are sent to the executors by value, so that executors need
numpy, pandas and pyarrow, and no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
