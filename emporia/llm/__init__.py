"""Operators for preparing large-scale training text.

Functions that run in Python workers are shipped by value, so the workers need
numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
