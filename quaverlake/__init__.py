"""Catalog analytics on Spark: DataFrame operators, sources, functions, plans and streams.

Functions handed to executors are pickled by value, so a cluster needs no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
