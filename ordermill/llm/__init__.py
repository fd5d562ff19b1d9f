"""Operators of a training-data pipeline; nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
