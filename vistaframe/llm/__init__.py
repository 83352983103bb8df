"""Operators for large training-data pipelines.

One module per operator; ``queries`` holds the registered queries. Functions
of this package run inside Python workers, so they are shipped by value:
executors need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
