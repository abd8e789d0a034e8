"""Operators for preparing language-model training data, and their queries.

Nothing outside this package imports it. Code that runs in Python workers travels with
the tasks, so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
