"""Operators for preparing language-model training data; nothing else in the package imports this subpackage.

Worker code travels with the job, so executors need no installation of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
