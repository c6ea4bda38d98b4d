"""Operators for large training-text pipelines.

Nothing else in the package imports this subpackage. Task code of this
subpackage is pickled by value, so executors need only the third-party
libraries, not a copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
