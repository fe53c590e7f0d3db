"""Operators for preparing training data: deduplication, mixing, tokenization, filtering and search.

Nothing else in the library imports this subpackage. :mod:`linkrank.llm.queries`
registers one query per operator.

Functions of this subpackage that run in Python workers are sent there by value, so
executors need NumPy, pandas and PyArrow but no copy of this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
