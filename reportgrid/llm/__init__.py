"""Operators that prepare training data: near-duplicates, filters, tokens, archives."""

import sys

from pyspark import cloudpickle

# functions sent to executors carry their code along: this package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
