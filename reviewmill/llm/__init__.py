"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Functions that run in Python workers travel by
value, so that a cluster needs no copy of this repository on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
