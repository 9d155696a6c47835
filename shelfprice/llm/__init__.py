"""Operators a training-data pipeline needs, one module each, and their registered queries.

Nothing else in the package imports this subpackage.  Functions that run in Python tasks
are shipped with the task, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
