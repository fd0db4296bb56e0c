"""Operators on training data, their queries and the SQL that gives the same rows.

Python functions of this subpackage are shipped to executors by value, so a
cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
