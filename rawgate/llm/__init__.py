"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped with the job, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
