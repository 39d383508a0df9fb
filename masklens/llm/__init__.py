"""Operators for preparing large text corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# executors need not have the package installed: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])
