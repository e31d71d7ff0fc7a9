"""Operators of a training-data pipeline; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their code, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
