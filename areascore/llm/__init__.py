"""Operators for preparing training data: mixing, deduplication, tokens, language, quality, privacy, shards.

Nothing else in the library imports this folder. Functions that run in Python workers are pickled by
value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
