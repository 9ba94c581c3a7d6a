"""Operators for preparing training text, and the queries that apply them.

Nothing else in the library imports this package.  Functions that run inside
tasks travel by value, so executors need the installed packages (numpy, pyarrow,
zstandard, ...) but no copy of this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
