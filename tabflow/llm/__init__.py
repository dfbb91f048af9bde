"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers one query per operator.
Nothing else in the library imports this package, and deleting it leaves
the rest working.  Functions that run inside Spark tasks are pickled by
value, so executors need numpy/pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
