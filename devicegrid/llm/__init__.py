"""Operators for preparing language-model training data, one module each.

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.  The
small Python helpers that run inside tasks travel with the tasks by value, so
that executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
