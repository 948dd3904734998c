"""Document-corpus analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package that run in tasks travel with the task, so that executors need no
# installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
