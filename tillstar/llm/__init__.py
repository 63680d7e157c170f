"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the package imports this one. Functions that run inside Python workers are shipped by
value, so a cluster needs the libraries but not this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
