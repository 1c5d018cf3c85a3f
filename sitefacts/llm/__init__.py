"""Operators that prepare text corpora for training language models. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors with their code, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
