"""Operators of a training-data pipeline and their queries.

Task functions of this package are pickled by value, so executors need no copy of it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
