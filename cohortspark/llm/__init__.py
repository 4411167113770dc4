"""Operators for preparing language-model training data.

Each module holds one operator with its own interface; ``queries`` registers one query per operator.
Functions of this package that run in Python workers travel with the job, so executors need no copy
of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
