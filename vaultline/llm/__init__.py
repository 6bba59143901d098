"""Training-data operators: one module per operator, queries in ``registry``.

Tasks get this package's functions by value, so executors need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
