"""Operators that prepare text corpora for training language models."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
