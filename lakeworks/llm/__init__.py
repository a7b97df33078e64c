"""Operators for training-data pipelines: deduplication, classifiers, scans, packing, chat.

Each module holds one operator with its own interface; :mod:`lakeworks.llm.queries`
registers the queries.  Functions that run in Python workers travel by value, so
the workers need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
