"""Operators for preparing training data. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks that call them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
