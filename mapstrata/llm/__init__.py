"""Operators that a training-data pipeline needs, as Spark jobs over documents, pages and vectors.

Functions of this package that run inside tasks travel with the job (pickled by value), so executors
need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
