"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; `queries` applies them to the test tables.
Functions of this package travel to the executors by value, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
