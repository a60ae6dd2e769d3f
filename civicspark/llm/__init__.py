"""Training-data operators: text, vector, page and conversation tables at corpus scale."""

import sys

from pyspark import cloudpickle

# Functions go to the Python workers by value, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
