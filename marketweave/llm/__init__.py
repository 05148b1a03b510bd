"""Operators for preparing training data: near copies, secrets, tokens, personal data, toxicity, benchmarks, language, search, archives."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that workers need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
